"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds its distinct runs of ``shingle`` words.  Documents
whose sets have a Jaccard similarity of at least ``percent`` % are linked.

1. Documents with equal sets are one representative, with a signature of
   minwise tokens (one permutation, a bin per token, empty bins filled from
   fixed other bins): a wide one for the root of each tree, and ``TOKENS`` of
   one byte each.
2. **Chosen paths.**  In each of ``TREES`` independent trees, a node selects
   a token by a hash of itself and sends a set to the child named by the
   set's value there; one node in ``BRANCH`` selects two.  Nodes of up to
   ``CHUNK`` sets are leaves: all their pairs are compared by signature (the
   many of up to ``LEAF`` sets a batch of leaves at a time).  Larger nodes
   branch on, level by level, until they are leaves.
3. **Alike nodes** would never become small: sets that are similar share
   nearly all tokens.  The sets of a large node are therefore first compared
   in chunks of ``CHUNK`` with a few sets in common.  If what hangs together
   with one of these holds at least half of the node, the node is done as soon
   as the sets outside have been compared with all of it, in tiles.
   Otherwise it branches.
4. What hangs together by signatures is a group; a similar pair that shares a
   leaf is always in one group.  Signatures only propose: nothing is linked by
   them.
5. **Full sets** confirm, in tiles of up to ``TILE_SETS`` sets and about
   ``TILE_SHINGLES`` shingles.  A small group is one tile.  Of a larger one,
   each tile is confirmed by itself, every text sent once; then the sets
   outside the group's largest confirmed component visit the other tiles in
   which a signature says that they may have a link to another component, and
   are confirmed there.  So whatever is similar within a group is linked, and no
   task ever holds more than a tile and its visitors.

The rows are the same whatever the layout.  With ``s`` the similarity of a pair, the chance to share a
leaf below a node is ``f(k) = (1 - q) s f(k - 1) + q (1 - (1 - s f(k - 1))^2)``
for k levels and q = 1 / BRANCH: at s = 0.85, 0.88 after one level, 0.78 after
two, 0.6 after five.  With eight trees a pair at the threshold is missed once in
thousands even at depth five; more similar pairs far more rarely, and a missed
link changes a row only if no other path connects
(``tests/llm/test_minhash_dedup.py`` measures it by similarity).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postcluster.llm.components import EDGES, components, forest
from postcluster.llm.frames import ROW, cut, drop, keep_only, map_texts
from postcluster.llm.words import mix64, run_hashes, scan, seeds64
from postcluster.session import open_folders

SHINGLE, PERCENT = 3, 85
TREES, TOKENS = 8, 128
LEAF = 64
#: One node in so many selects two tokens.
BRANCH = 5
#: A node this deep does not branch any more, whatever its size.
DEEPEST = 64
CHUNK, COMMON = 512, 4
#: Sets of a tile, and sets from outside that meet it at a time.
TILE_SETS, PROBES = 2048, 4096
TILE_SHINGLES = 1 << 20
#: A signature may underrate a pair by so many standard deviations.
DEVIATIONS = 4.5
#: Token comparisons made at a time.
COMPARED = 1 << 22

_BINS = TREES + TOKENS
_EMPTY = np.uint32(0xFFFFFFFF)
_FILL = seeds64(64, 301)
_ROOTS = seeds64(64, 302)
_PICK = seeds64(4, 303)


# --- sets and signatures -------------------------------------------------------

def shingle_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """Each text's set: sorted distinct 64-bit hashes of its word runs.  A text
    with fewer words has its whole sequence; one without words has none."""
    words = scan(texts, lower=True)
    hashes = words.hashes()
    runs = run_hashes(hashes, shingle)
    none, out = np.zeros(0, np.uint64), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(runs[a:b - shingle + 1]))
        else:
            out.append(run_hashes(hashes[a:b], b - a) + np.uint64(b - a) if b > a else none)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """uint8[sets, 4 * TREES + TOKENS]: the roots' tokens, then those of one
    byte; rows of empty sets mean nothing."""
    size = np.array([len(s) for s in sets], np.int64)
    sig = np.full((len(sets), _BINS), _EMPTY, np.uint32)
    if size.sum():
        mixed = mix64(np.concatenate(sets) ^ np.uint64(0x5DEECE66D1234567))
        at = np.repeat(np.arange(len(sets)), size) * _BINS + (mixed % np.uint64(_BINS)).astype(np.int64)
        low = ((mixed >> np.uint64(32)).astype(np.uint32)) & np.uint32(0xFFFFFFFE)
        np.minimum.at(sig.reshape(-1), at, low)
    full = size > 0
    filled, bins = sig.copy(), np.arange(_BINS, dtype=np.uint64)
    for seed in _FILL:  # an empty bin takes the value of the first filled bin on its list
        row, col = np.nonzero((filled == _EMPTY) & full[:, None])
        if not len(row):
            break
        source = (mix64(bins + seed) % np.uint64(_BINS)).astype(np.int64)
        filled[row, col] = sig[row, source[col]]
    row, col = np.nonzero((filled == _EMPTY) & full[:, None])
    for step in range(1, _BINS if len(row) else 0):
        still = filled[row, col] == _EMPTY
        filled[row[still], col[still]] = sig[row[still], (col[still] + step) % _BINS]
    with np.errstate(over="ignore"):
        small = ((filled[:, TREES:] * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    roots = np.ascontiguousarray(filled[:, :TREES]).view(np.uint8).reshape(len(sets), 4 * TREES)
    return np.concatenate([roots, small], axis=1)


def _signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 4 * TREES + TOKENS)


def _tokens(column: pa.Array) -> np.ndarray:
    return _signature_rows(column)[:, 4 * TREES:]


def _sums(sets: list[np.ndarray], seed: int) -> np.ndarray:
    return np.array([mix64(s + np.uint64(seed)).sum(dtype=np.uint64) if len(s) else 0 for s in sets],
                    np.uint64).view(np.int64)


def _signed(df: DataFrame, text: str, id_col: str, shingle: int) -> DataFrame:
    """``id, th, n, k1, k2, sig`` of every row: text hash, set size, set key
    (128 bits) and signature."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.xxhash64(F.col(f"`{text}`").cast("string")).alias("th"),
                     F.col(f"`{text}`").cast("string").alias("text"))

    def make():
        def work(texts: pa.Array) -> list:
            sets = shingle_sets(texts, shingle)
            sig = signatures(sets)
            return [pa.array([len(s) for s in sets], pa.int64()), pa.array(_sums(sets, 1)), pa.array(_sums(sets, 2)),
                    pa.array([r.tobytes() for r in sig], pa.binary())]
        return work

    made = map_texts(rows, "text", ["id", "th"], "n long, k1 long, k2 long, sig binary", make)
    return made.select(f"{ROW}.id", f"{ROW}.th", "n", "k1", "k2", "sig")


# --- pairs by signature ----------------------------------------------------------

def _may_reach(equal: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """True where two different sets of n and m shingles, equal in so many
    tokens, may reach the threshold.  Few shingles fill few bins, so their
    tokens say less."""
    low, high = np.minimum(n, m), np.maximum(n, m)
    fits = 100 * np.where(low == high, low - 1, low) >= percent * np.where(low == high, high + 1, high)
    p = percent / 100
    least = p - DEVIATIONS * np.sqrt(p * (1 - p) / np.minimum(low, TOKENS).clip(1))
    return fits & (equal >= least * TOKENS)


def _equal_tokens(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many tokens each row of x shares with each row of y."""
    if len(x) * len(y) < 4096:
        return (x[:, None, :] == y[None, :, :]).sum(axis=2)
    out = np.zeros((len(x), len(y)), np.uint8)  # at most TOKENS
    for t in range(x.shape[1]):
        out += x[:, t][:, None] == y[:, t]
    return out


def _edges(a: np.ndarray, b: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _stars(rep: np.ndarray, i: list[np.ndarray], j: list[np.ndarray]) -> pa.Table:
    """What some pairs of rows connect, as stars of their representatives."""
    if not i:
        return _edges(rep[:0], rep[:0])
    return _edges(*forest(rep[np.concatenate(i)], rep[np.concatenate(j)]))


def _leaves(percent: int):
    """(node, rep, n, sig) sorted by node -> stars of what is similar in the
    same node.  All nodes of a batch are compared together."""
    def compare(rows: pa.Table) -> pa.RecordBatch:
        node, rep, n = (rows.column(c).to_numpy() for c in ("node", "rep", "n"))
        tokens = _tokens(rows.column("sig"))
        end = np.searchsorted(node, node, side="right")
        partners = end - np.arange(len(node)) - 1
        found_i, found_j, at = [], [], 0
        total = np.concatenate([[0], np.cumsum(partners)])
        while at < len(node):  # rows with all their partners, a bounded number of pairs at a time
            to = max(at + 1, int(np.searchsorted(total, total[at] + COMPARED // TOKENS, side="right")) - 1)
            i = np.repeat(np.arange(at, to), partners[at:to])
            j = i + 1 + np.arange(len(i)) - np.repeat(total[at:to] - total[at], partners[at:to])
            fits = _may_reach((tokens[i] == tokens[j]).sum(axis=1), n[i], n[j], percent)
            found_i.append(i[fits])
            found_j.append(j[fits])
            at = to
        return _stars(rep, found_i, found_j).combine_chunks().to_batches(max_chunksize=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            node = rows.column("node").to_numpy()
            whole = int(np.searchsorted(node, node[-1])) if len(node) else 0  # the last node may go on
            if whole:
                yield from compare(rows.slice(0, whole))
            held = rows.slice(whole)
        if held is not None and held.num_rows:
            yield from compare(held)
    return run


CHUNKED = "node long, rep long, label long, b long"


def _chunk(percent: int):
    """(node, rep, n, sig, common) of a chunk -> rows (rep, b): stars of what is
    similar in it; and rows (node, rep, label): the first of the node's common
    sets that a set hangs together with here, or else itself."""
    def run(table: pa.Table) -> pa.Table:
        rep, n, tokens = table.column("rep").to_numpy(), table.column("n").to_numpy(), _tokens(table.column("sig"))
        found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(rep), 64):
            part = np.arange(at, min(at + 64, len(rep)))
            i, j = np.nonzero(_may_reach(_equal_tokens(tokens[part], tokens), n[part][:, None], n, percent))
            below = part[i] < j
            found_i.append(part[i[below]])
            found_j.append(j[below])
        low, high = forest(np.concatenate(found_i), np.concatenate(found_j))
        root = np.arange(len(rep))
        root[low] = high
        common = table.column("common").to_numpy()
        best = np.full(len(rep), np.iinfo(np.int64).max)
        np.minimum.at(best, root[common], rep[common])
        label = np.where(best[root] < np.iinfo(np.int64).max, best[root], rep)
        empty = pa.nulls(len(low), pa.int64())
        return pa.table({
            "node": pa.concat_arrays([empty, pa.array(table.column("node").to_numpy())]),
            "rep": pa.array(np.concatenate([rep[low], rep])),
            "label": pa.concat_arrays([empty, pa.array(label)]),
            "b": pa.concat_arrays([pa.array(rep[high]), pa.nulls(len(rep), pa.int64())])})
    return run


def _tile_pairs(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rep, i, j) of the rows i marked ``probe`` that may be similar to the
    other rows j of another ``label``."""
    rep, n, label = (table.column(c).to_numpy() for c in ("rep", "n", "label"))
    probe = table.column("probe").to_numpy()
    tokens = _tokens(table.column("sig"))
    second = np.flatnonzero(~probe)
    for part in np.array_split(np.flatnonzero(probe), 1 + int(probe.sum()) // 64):
        may = _may_reach(_equal_tokens(tokens[part], tokens[second]), n[part][:, None], n[second], percent)
        i, j = np.nonzero(may & (label[part][:, None] != label[second]))
        yield rep, part[i], second[j]


def _connect_tile(percent: int):
    def run(table: pa.Table) -> pa.Table:
        found = list(_tile_pairs(table, percent))
        return _stars(table.column("rep").to_numpy(), [i for _, i, _ in found], [j for _, _, j in found])
    return run


# --- the trees --------------------------------------------------------------------

def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, rep) of the first level of all trees, from (rep, sig)."""
    for batch in batches:
        wide = np.ascontiguousarray(_signature_rows(batch.column("sig"))[:, :4 * TREES]).view(np.uint32)
        for t in range(TREES):
            with np.errstate(over="ignore"):
                node = mix64(_ROOTS[t] * wide[:, t].astype(np.uint64) + _ROOTS[TREES + t])
            yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), batch.column("rep")], names=["node", "rep"])


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, rep) of the next level, from (node, rep, sig)."""
    for batch in batches:
        node, rep = batch.column("node").to_numpy().view(np.uint64), batch.column("rep")
        tokens = _tokens(batch.column("sig"))
        with np.errstate(over="ignore"):
            twice = mix64(node + _PICK[2]) % np.uint64(BRANCH) == 0
            for branch, rows in ((0, np.arange(len(node))), (1, np.flatnonzero(twice))):
                chosen = mix64(node[rows] + _PICK[branch]) % np.uint64(TOKENS)
                value = tokens[rows, chosen.astype(np.int64)].astype(np.uint64)
                child = mix64(mix64(node[rows] * _PICK[3] + value) + chosen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(child.view(np.int64)), rep.take(pa.array(rows))], names=["node", "rep"])


def _spread(count: Column) -> Column:
    """A row for each number below ``count``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))


def _ceil(of: str, by: int) -> Column:
    return F.expr(f"CAST(ceil({of} / {by}) AS BIGINT)")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def candidates(reps: DataFrame, percent: int = PERCENT, leaf: int = LEAF) -> DataFrame:
    """``a, b`` from ``rep, n, sig``: edges that connect whatever pairs of the
    trees' leaves may be similar."""
    by_rep = reps.select("rep", "n", "sig")
    rows = cut(by_rep.select("rep", "sig").mapInArrow(_roots, "node long, rep long"))
    leaves: list[DataFrame] = []
    chunked: list[DataFrame] = []
    outside: list[DataFrame] = []
    for level in range(DEEPEST):
        sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        sized = cut(rows.join(sizes, "node").select("node", "rep", "size"))
        drop(rows)
        leaves.append(sized.where(F.col("size") <= leaf))
        large = sized.where(F.col("size") > leaf)
        if large.isEmpty():
            break
        chunked.append(cut(_chunks(large, by_rep, percent)))
        labelled = chunked[-1].where("b IS NULL").groupBy("node", "rep").agg(F.min("label").alias("label"))
        most = labelled.groupBy("node", "label").agg(F.count("*").alias("members")).groupBy("node").agg(
            F.sum("members").alias("size"), F.max("members").alias("most"),
            F.max_by("label", F.struct("members", "label")).alias("main"))
        alike = (2 * F.col("most") >= F.col("size")) | F.lit(level + 1 == DEEPEST)
        # A node that is one chunk has been compared as a whole.
        open_ = most.where((F.col("most") < F.col("size")) & (F.col("size") > CHUNK))
        marked = cut(labelled.join(open_.withColumn("alike", alike), "node"))
        outside.append(marked.where("alike"))
        rows = cut(marked.where("NOT alike").select("node", "rep").join(by_rep.select("rep", "sig"), "rep").select(
            "node", "rep", "sig").mapInArrow(_grow, "node long, rep long").distinct())
    found = [
        _union(leaves).select("node", "rep").join(by_rep, "rep").select("node", "rep", "n", "sig").repartition("node")
        .sortWithinPartitions("node").mapInArrow(_leaves(percent), EDGES),
        *[c.where("b IS NOT NULL").select(F.col("rep").alias("a"), "b") for c in chunked],
        *([_outside(_union(outside), by_rep, percent)] if outside else []),
    ]
    return cut(_union(found).distinct())


def _chunks(large: DataFrame, by_rep: DataFrame, percent: int) -> DataFrame:
    """Edges and labels within chunks of about ``CHUNK`` sets of a node; each
    chunk also has ``COMMON`` sets that all of the node's chunks have."""
    count = _ceil("size", CHUNK)
    dealt = large.select("node", "rep", F.pmod(F.xxhash64("rep", "node"), count).alias("chunk"), F.lit(False).alias("common"))
    common = large.groupBy("node", "size", F.pmod(F.xxhash64("rep"), F.lit(COMMON)).alias("part")).agg(
        F.min("rep").alias("rep")).select("node", "rep", _spread(count).alias("chunk"), F.lit(True).alias("common"))
    each = dealt.union(common).groupBy("node", "chunk", "rep").agg(F.max("common").alias("common"))
    return each.join(by_rep, "rep").groupBy("node", "chunk").applyInArrow(_chunk(percent), CHUNKED)


def _outside(marked: DataFrame, by_rep: DataFrame, percent: int) -> DataFrame:
    """Edges between the sets of a node (``node, rep, label, size, main, most``)
    without its main label and all of the node, tile by tile."""
    chunks, parts = _ceil("size", TILE_SETS), _ceil("(size - most)", PROBES)
    base = marked.select("node", F.pmod(F.xxhash64("rep", "node"), chunks).alias("chunk"), _spread(parts).alias("part"),
                         "rep", "label", F.lit(False).alias("probe"))
    probes = marked.where("label <> main").select(
        "node", _spread(chunks).alias("chunk"), F.pmod(F.xxhash64("node", "rep"), parts).alias("part"),
        "rep", "label", F.lit(True).alias("probe"))
    return base.union(probes).join(by_rep, "rep").groupBy("node", "chunk", "part").applyInArrow(
        _connect_tile(percent), EDGES)


# --- confirmation on full sets ------------------------------------------------------

class Tile:
    """Full sets, numbered so that all intersections with one set are one pass."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray], label: np.ndarray, percent: int):
        self.ids, self.label, self.percent = ids, label, percent
        self.n = np.array([len(s) for s in sets], np.int64)
        self.tokens = signatures(sets)[:, 4 * TREES:]
        names, self.members = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True)
        self.mark = np.zeros(len(names), bool)
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        self.found: list[tuple[int, int]] = []

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of some other rows whose full sets are similar to row i's."""
        own = self.members[self.first[i]:self.first[i + 1]]
        self.mark[own] = True
        size = self.n[others]
        skip = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.first[others] - skip, size)
        both = np.add.reduceat(self.mark[self.members[at]].astype(np.int64), skip)
        self.mark[own] = False
        return others[100 * both >= self.percent * (self.n[i] + size - both)]

    def connect(self, rows: np.ndarray, others: np.ndarray) -> None:
        """Compare each of some rows with others of another label (that come
        after it, if they are the same rows), and give what is similar one label."""
        once = rows is others
        for part in np.array_split(rows, 1 + len(rows) // 64):
            may = _may_reach(_equal_tokens(self.tokens[part], self.tokens[others]),
                             self.n[part][:, None], self.n[others], self.percent)
            for k, i in enumerate(part.tolist()):
                may_k = may[k] & (others > i) if once else may[k]
                open_ = others[may_k & (self.label[others] != self.label[i])]
                good = self.linked(i, open_) if len(open_) else open_
                if len(good):
                    labels, one = np.unique(self.label[good], return_index=True)
                    self.found += [(self.ids[i], self.ids[j]) for j in good[one]]
                    self.label[np.isin(self.label, labels)] = self.label[i]

    def edges(self) -> pa.Table:
        return _edges(np.array([a for a, _ in self.found], np.int64), np.array([b for _, b in self.found], np.int64))


def _sets(table: pa.Table, shingle: int) -> list[np.ndarray]:
    return shingle_sets(pa.concat_arrays(table.column("text").chunks), shingle) if table.num_rows else []


def _confirm_tile(shingle: int, percent: int):
    """(id, text) of a tile -> links that connect whatever is similar in it."""
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        tile = Tile(ids, _sets(table, shingle), np.arange(len(ids)), percent)
        rows = np.arange(len(ids))
        tile.connect(rows, rows)
        return tile.edges()
    return run


def _confirm_visit(shingle: int, percent: int):
    """(id, text, label, visitor) of a tile and its visitors -> links between them."""
    def run(table: pa.Table) -> pa.Table:
        visitor = table.column("visitor").to_numpy()
        tile = Tile(table.column("id").to_numpy(), _sets(table, shingle), table.column("label").to_numpy().copy(), percent)
        tile.connect(np.flatnonzero(visitor), np.flatnonzero(~visitor))
        return tile.edges()
    return run


def _visits(percent: int):
    """A tile's signatures and those of sets from other tiles -> the sets that
    may have a link here to another component than theirs."""
    def run(table: pa.Table) -> pa.Table:
        rep = table.column("rep").to_numpy()
        here = [rep[np.unique(i)] for rep, i, _ in _tile_pairs(table, percent)]
        ids = np.concatenate(here) if here else rep[:0]
        same = {c: table.column(c)[0].as_py() for c in ("group", "tile")}
        return pa.table({"id": pa.array(ids, pa.int64()), "group": pa.array([same["group"]] * len(ids), pa.int64()),
                         "tile": pa.array([same["tile"]] * len(ids), pa.int64())})
    return run


def links(docs: DataFrame, reps: DataFrame, edges: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Confirmed links ``a, b`` that connect whatever is similar within what
    ``edges`` connect.  ``docs`` has ``id, th, text``."""
    groups = components(edges)
    of_group = groups.union(groups.select(F.col("component").alias("id"), "component").distinct())
    member = of_group.select("id", F.col("component").alias("group")).join(
        reps.select(F.col("rep").alias("id"), "th", "n", "sig"), "id")
    tiles = F.greatest(F.expr(f"CAST(ceil(sum(n) / {TILE_SHINGLES}) AS BIGINT)"),
                       F.expr(f"CAST(ceil(count(*) / {TILE_SETS}) AS BIGINT)"))
    member = cut(member.join(member.groupBy("group").agg(tiles.alias("tiles")), "group").withColumn(
        "tile", F.pmod(F.xxhash64("id"), F.col("tiles"))))

    def texts(of: DataFrame) -> DataFrame:
        """One text of each set, wherever it is to be confirmed."""
        return docs.join(of, ["id", "th"]).dropDuplicates(["id", "th"])

    first = cut(texts(member.select("id", "th", "group", "tile")).select("id", "text", "group", "tile").groupBy(
        "group", "tile").applyInArrow(_confirm_tile(shingle, percent), EDGES))
    large = member.where("tiles > 1")
    if large.isEmpty():
        drop(member)
        return first
    # Sets outside the largest confirmed component of their group visit its other tiles.
    confirmed = components(first.join(large.select(F.col("id").alias("a")), "a", "left_semi").select("a", "b"))
    labelled = large.join(confirmed, "id", "left").withColumn("label", F.coalesce("component", "id"))
    main = labelled.groupBy("group", "label").agg(F.count("*").alias("members")).groupBy("group").agg(
        F.max_by("label", F.struct("members", "label")).alias("main"),
        (F.sum("members") - F.max("members")).alias("outside"))
    labelled = cut(labelled.join(main.where("outside > 0"), "group").select(
        "id", "th", "n", "sig", "group", "tile", "tiles", "label", "outside", (F.col("label") != F.col("main")).alias("stray")))
    parts = _ceil("outside", PROBES)
    base = labelled.select("group", "tile", _spread(parts).alias("part"), F.col("id").alias("rep"), "n", "sig", "label",
                           F.lit(False).alias("probe"))
    probes = labelled.where("stray").withColumn("to", _spread(F.col("tiles"))).where("`to` <> tile").select(
        "group", F.col("to").alias("tile"), F.pmod(F.xxhash64("id", "group"), parts).alias("part"),
        F.col("id").alias("rep"), "n", "sig", "label", F.lit(True).alias("probe"))
    visits = cut(base.union(probes).groupBy("group", "tile", "part").applyInArrow(
        _visits(percent), "id long, group long, tile long").distinct())
    # A tile meets its visitors about a tile's worth of shingles at a time.
    known = labelled.select("id", "th", "n", "label")
    weight = visits.join(known.select("id", "n"), "id").groupBy("group", "tile").agg(
        F.expr(f"CAST(ceil(sum(n) / {TILE_SHINGLES}) AS BIGINT)").alias("turns"))
    text = texts(labelled.select("id", "th")).select("id", "text")
    guests = visits.join(weight, ["group", "tile"]).select(
        "id", "group", "tile", F.pmod(F.xxhash64("id", "tile"), F.col("turns")).alias("turn"), F.lit(True).alias("visitor"))
    hosts = labelled.select("id", "group", "tile").join(weight, ["group", "tile"]).select(
        "id", "group", "tile", _spread(F.col("turns")).alias("turn"), F.lit(False).alias("visitor"))
    both = guests.union(hosts).join(known.select("id", "label"), "id").join(text, "id")
    second = cut(both.groupBy("group", "tile", "turn").applyInArrow(_confirm_visit(shingle, percent), EDGES))
    drop(member, labelled, visits)
    return first.union(second)


def near_documents(df: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, text: str = "text",
                   id_col: str = "doc_id", leaf: int = LEAF) -> DataFrame:
    """``id, th, n_shingles, component_id, kept`` for every row (``th``: a hash
    of its text, to tell rows of one id apart).

    Null, empty and blank texts have an empty set and link with nothing.  A
    null id links with nothing, has no component and is kept.  Rows with one
    id and equal sets count as one document, which is its own component's
    candidate for staying.
    """
    spark = df.sparkSession
    before = open_folders(spark)
    signed = cut(_signed(df, text, id_col, shingle))
    reps = cut(signed.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("k1", "k2").agg(
        F.min(F.struct("id", "th")).alias("r"), F.first("n").alias("n"), F.first("sig").alias("sig"),
    ).select("k1", "k2", F.col("r.id").alias("rep"), F.col("r.th").alias("th"), "n", "sig"))
    edges = candidates(reps, percent, leaf)
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.xxhash64(F.col(f"`{text}`").cast("string")).alias("th"),
                     F.col(f"`{text}`").cast("string").alias("text"))
    groups = cut(components(links(docs, reps, edges, shingle, percent)))
    keep_only(spark, before, signed, reps, groups)
    known = reps.select("k1", "k2", "rep").join(groups, F.col("rep") == F.col("id"), "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component"))
    empty = (F.col("n") == 0) | F.col("id").isNull()
    keyed = signed.select("id", "th", "n", F.when(~empty, F.col("k1")).alias("k1"), F.when(~empty, F.col("k2")).alias("k2"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return keyed.join(known, ["k1", "k2"], "left").select(
        "id", "th", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
