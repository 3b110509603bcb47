"""Exact n-gram Jaccard self-join with adaptive multi-match prefixes, and the connected groups that its links make.

A document's set holds the 64-bit hashes of its distinct k-word shingles; documents link when 100 * |x & y| >= percent *
|x | y|, so each has at least o = ceil(percent * n / 100) of its n tokens in common with any partner.  Order the tokens of all sets
alike, rarest first: then the first n - o + l tokens of both partners share at least l tokens, for every l.  Each document picks its own l by cost: a longer prefix means more rows but asks for
more matches before verification.  A pair is a candidate when its prefixes share at least the smaller l of the two, and as many more as
the two sizes ask for.

What keeps it linear where texts repeat:
- equal sets are joined first, by a 128-bit fingerprint; from then on each different set is one node, whose text is
  that of one of its rows;
- each node is verified with the hub (smallest node) that it shares most prefix tokens with; whole families of near copies link here;
  a hub's pairs are dealt over several tasks, by the tokens in them;
- only pairs of different groups so far are looked at further: pairs of rows in token lists up to `small_list`
  long, and blocks that are compared in memory in longer lists, of which only the links that join groups leave.

Long lists: two sets that share e tokens meet in e lists, so each set stays in all but e - 1 of its own, the longest, and still
meets its partners in one.  Pairs inside the largest group of a list need no look, so only sets outside it are sent to every block
of the list, the others to one.  Lists that hang together by common nodes are taken as one where that saves comparisons.  Blocks are
bounded by the tokens in them.

Statistics: one pass counts all shingles and all words of all documents in `2**sketch_bits` hashed counters each.  Those of shingles find
passages that many documents share; those of words tell chance meetings of frequent words from rare shingles.  Both only order tokens
and choose l, and any order gives the same links.

Rules: null texts and texts without words have the empty set and link with nothing; a text of fewer than k words is one
shingle; texts of any length are read whole; every row is a document of its own, also where rows share a doc_id or have none: component_id is
the smallest doc_id among the rows that are linked (null if they have none); an empty table gives none; columns beyond doc_id and text are
ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .common import column, drop_stored, give_back, hash_words, mix64, shared, slices, stored, table, words, working

SKETCH_BITS = 20
#: The largest l (long sets may have one more per 40 tokens), and what verifying a pair costs in units of reading one prefix entry.
MOST_MATCHES, VERIFY_COST = 8, 8.0
#: Token lists up to this length give pairs of rows; longer ones are compared block by block, with about so many tokens in a block.
SMALL_LIST, BLOCK = 48, 400_000
#: Bits of the filter that tells which documents' sets are needed; it only saves work.
FILTER_BITS = 23
_PART_BITS = 16
#: Rows (two numbers each) that are broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Edges of a graph for each file that its labels are written to.
EDGES_PER_FILE = 200_000
#: Stands for a null doc_id where rows are looked up.
_NO_ID = -(1 << 63)


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's k-word shingles."""
    return [s for s, _ in scored_sets(texts, k)]


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The counters of hashes, by their first bits."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def scored_sets(texts: list[str | None], k: int, scores: np.ndarray | None = None, counter: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """The sets, and how common each shingle is to be expected: the sum of its words' scores (word_scores(); none: 0).

    The words are counted in counter, if there is one.
    """
    split = [words(t if t.islower() else t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")) if t else [] for t in texts]
    count = np.array([len(ws) for ws in split], np.int64)
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * len(split)
    if not count.sum():
        return out
    code, unique = pd.factorize(np.array([w for ws in split for w in ws], dtype=object))
    h = hash_words(list(unique))
    if counter is not None:
        np.add.at(counter, _places(h, len(counter).bit_length() - 1), np.bincount(code, minlength=len(h)).astype(counter.dtype))
    own = np.zeros(len(code), np.int64) if scores is None else scores[_places(h, len(scores).bit_length() - 1)].astype(np.int64)[code]
    h, score = h[code], own.copy()
    rolled = mix64(h)
    with np.errstate(over="ignore"):
        for i in range(1, k):
            rolled[: len(h) - i] = mix64(rolled[: len(h) - i] * np.uint64(0x9E3779B97F4A7C15) + h[i:])
            score[: len(h) - i] += own[i:]
        start = 0
        for d, n in enumerate(count.tolist()):
            if n >= k:
                tokens, first = np.unique(rolled[start : start + n - k + 1], return_index=True)
                out[d] = tokens, score[start + first]
            elif n:
                x = np.uint64(n)
                for v in h[start : start + n]:
                    x = mix64(np.array([x * np.uint64(0x9E3779B97F4A7C15) + v], np.uint64))[0]
                out[d] = np.array([x], np.uint64), np.zeros(1, np.int64)
            start += n
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _at_least(n: np.ndarray | int, percent: int):
    return -(-percent * n // 100)


def fingerprints(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Two 64-bit sums over each set's tokens, which tell different sets apart."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    ends = np.cumsum([len(s) for s in sets]).astype(np.int64)
    out = []
    for salt in (0, 0xA5A5A5A5A5A5A5A5):
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(flat ^ np.uint64(salt)))])
            out.append(_signed(sums[ends] - sums[np.concatenate([[0], ends[:-1]])] if len(ends) else sums[:0]))
    return out


def _first_pass(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """A row (doc_id, columns of docs beyond text, n, fp1, fp2) per document, and per task the counters as compressed
    pieces (n: the task, part, counts): first those of shingles, then those of words."""
    others = docs.columns[2:]
    names = ["doc_id", "n", "fp1", "fp2", "part", "counts", *others]

    def run(batches):
        both = np.zeros((2, 1 << bits), np.int32)
        counter, of_words = both
        kinds = [pa.int64()] * len(others)
        for batch in batches:
            for piece in slices(batch):
                sets = [s for s, _ in scored_sets(column(piece, "text"), k, counter=of_words)]
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                places = _places(flat, bits)
                np.add.at(counter, places, 1) if len(places) < 1 << bits - 3 else np.add(counter, np.bincount(places, minlength=1 << bits).astype(np.int32), out=counter)
                fp, n = fingerprints(sets), len(sets)
                yield pa.RecordBatch.from_arrays([piece.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp[0]), pa.array(fp[1]), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *(piece.column(2 + i).cast(t) for i, t in enumerate(kinds))], names)
        size = 1 << min(bits, _PART_BITS)
        if both.any():
            parts = [zlib.compress(p.tobytes(), 1) for p in both.reshape(-1, size)]
            none, task = pa.nulls(len(parts), pa.int64()), pa.array([TaskContext.get().partitionId()] * len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays([none, task, none, none, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary()), *(pa.nulls(len(parts), t) for t in kinds)], names)
        give_back()

    return docs.mapInArrow(run, "doc_id long, n long, fp1 long, fp2 long, part int, counts binary" + "".join(f", {c} long" for c in others))


def _sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """The tasks' counters of shingles and of words added up, in two steps of about the root of their number; the sum has a fixed size and goes to
    the driver."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for c in pdf["counts"]:
            x = np.frombuffer(zlib.decompress(c), np.int32 if len(zlib.decompress(c)) == 4 << min(bits, _PART_BITS) else np.int64).astype(np.int64)
            total = x if total is None else total + x
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "step": [0], "counts": [zlib.compress(total.tobytes(), 1)]})

    shape = "part int, step int, counts binary"
    rows = rows.where(F.col("part").isNotNull())
    steps = math.isqrt((rows.agg(F.max("n")).first()[0] or 0) + 1) + 1
    once = rows.select("part", (F.col("n") % steps).cast("int").alias("step"), "counts").groupBy("part", "step").applyInPandas(add, shape)
    out = np.zeros(2 << bits, np.int64)
    size = 1 << min(bits, _PART_BITS)
    for r in once.groupBy("part").applyInPandas(add, shape).collect():
        out[r.part * size : (r.part + 1) * size] = np.frombuffer(zlib.decompress(r.counts), np.int64)
    return out.reshape(2, -1)


def word_scores(counts: np.ndarray) -> np.ndarray:
    """The score of each counter of words: log2 of the count, rounded."""
    return np.log2(np.maximum(counts, 1)).round().astype(np.int8)


def prefixes(sets: list[tuple[np.ndarray, np.ndarray]], sketch: np.ndarray, percent: int, most: int = MOST_MATCHES) -> list[tuple[int, np.ndarray]]:
    """(l, prefix tokens) of each set (tokens, scores): rarest first, with the l of least estimated cost.

    Tokens that the counters show to be frequent come last; among the others those of common words come later.
    """
    bits = np.uint64(64 - int(len(sketch)).bit_length() + 1)
    mean = sketch.mean()
    out = []
    for s, score in sets:
        n = len(s)
        if not n:
            out.append((0, s))
            continue
        # counters hold other tokens too: what is above the mean counts as the token's own
        df = np.maximum(sketch[(s >> bits).astype(np.int64)] - mean, 1.0)
        level = np.log2(np.maximum(df / (mean + 2), 1)).astype(np.int64)
        order = np.lexsort((mix64(s), score, level))
        o = int(_at_least(n, percent))
        most_here = min(most + n // 40, o)
        sums = np.cumsum(df[order])[n - o : n - o + most_here]
        ell = 1 + int(np.argmin(sums * (1 + VERIFY_COST / np.arange(1, most_here + 1))))
        out.append((ell, s[order[: n - o + ell]]))
    return out


def _prefix_rows(docs: DataFrame, k: int, sketch: np.ndarray, percent: int, most: int) -> DataFrame:
    """key, n, fp1, fp2, ell and the prefix tokens of every row (key, text) of docs."""
    of_shingles, of_words = sketch
    held = shared(docs.sparkSession, (of_shingles.astype(np.float32 if of_shingles.max(initial=0) < 1 << 24 else np.float64), word_scores(of_words)))

    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                sketch, scores = held.value
                sets = scored_sets(column(piece, "text"), k, scores)
                found, fp = prefixes(sets, sketch, percent, most), fingerprints([s for s, _ in sets])
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([len(s) for s, _ in sets], pa.int64()), pa.array(fp[0]), pa.array(fp[1]), pa.array([e for e, _ in found], pa.int32()), pa.array([_signed(t) for _, t in found], pa.list_(pa.int64()))], [*_NAME, "ell", "tokens"])
        give_back()

    return docs.mapInArrow(run, "key long, n long, fp1 long, fp2 long, ell int, tokens array<long>")


#: What finds the row that stands for a node: its doc_id, and its set's size and fingerprint.
_NAME = ["key", "n", "fp1", "fp2"]


def _sets_of(docs: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """(doc, set) of the nodes in needed (doc and what finds its row); docs has (key, text).

    A filter of fixed size drops most other rows while texts are read.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))
    maps = needed.select(bit("key").alias("b")).groupBy(F.bitmap_bucket_number("b").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).collect()
    held = shared(docs.sparkSession, {r.bucket: bytes(r.bits) for r in maps})
    hashed = docs.select("key", "text", F.bitmap_bucket_number(bit("key")).alias("bucket"), F.bitmap_bit_position(bit("key")).alias("position"))

    def run(batches):
        bits = held.value
        for batch in batches:
            keep = [bool((own := bits.get(i)) and own[p >> 3] >> (p & 7) & 1) for i, p in zip(column(batch, "bucket"), column(batch, "position"), strict=True)]
            batch = batch.select(["key", "text"]).filter(pa.array(keep, pa.bool_()))
            for piece in slices(batch):
                sets = shingle_sets(column(piece, "text"), k)
                fp = fingerprints(sets)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp[0]), pa.array(fp[1]), pa.array([_signed(s) for s in sets], pa.list_(pa.int64()))], [*_NAME, "set"])
        give_back()

    found = hashed.mapInArrow(run, "key long, n long, fp1 long, fp2 long, set array<long>")
    return found.join(needed, _NAME).dropDuplicates(_NAME).select("doc", "set")


def _least_shared(percent: int) -> Column:
    """How many prefix tokens linked sets (nx, ellx and ny, elly) share at least.

    Linked sets have a = percent * (nx + ny) / (100 + percent) tokens in common.  Of the set whose prefix ends first, the n - (n - o + l)
    tokens behind its prefix are common at most, and its common tokens in the prefix are in the other's prefix too.
    """
    both = F.ceil(F.lit(percent) * (F.col("nx") + F.col("ny")) / F.lit(float(100 + percent)) - 1e-6)
    needs = [both - F.ceil(F.lit(percent) * F.col("n" + c) / F.lit(100.0) - 1e-6) + F.col("ell" + c) for c in "xy"]
    return F.greatest(F.least("ellx", "elly").cast("long"), F.least(*needs))


def _verified(pairs: DataFrame, sets: DataFrame, size: DataFrame, percent: int, block: int, together: bool) -> DataFrame:
    """Those pairs (x, y) whose sets are similar enough; size has (doc, n).

    Pairs of one y share a cell, or with together=True those whose x have the same least neighbour, as the pairs of a family mostly do; pairs of a
    cell of more than about `block` tokens are dealt over several, by x.  A set travels once to each cell, and cells are packed into groups of
    about that size.
    """
    if together:
        both = pairs.select("x", "y").union(pairs.select("y", "x"))
        least = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low")).select(F.col("node").alias("x"), F.least("node", "low").alias("cell"))
        pairs = pairs.join(least, "x")
    else:
        pairs = pairs.withColumn("cell", F.col("y"))
    held = pairs.select("cell", F.col("x").alias("doc")).distinct().join(size, "doc")
    fans = held.groupBy("cell").agg(F.ceil(F.sum("n") / F.lit(block)).cast("int").alias("fan"))
    rows = pairs.join(fans, "cell").select("x", "y", "cell", F.pmod(F.xxhash64("x"), F.col("fan")).cast("int").alias("part"))
    rows = stored(rows)
    ends = rows.select("cell", "part", F.col("x").alias("doc")).union(rows.select("cell", "part", "y")).distinct()
    count, total = ends.join(size, "doc").agg(F.count("*"), F.sum("n")).first()
    group = F.pmod(F.xxhash64("cell", "part"), F.lit(1 + 4 * (total or 0) // block)).alias("cells")
    members = ends.select(group, "doc").distinct()
    members = sets.join(F.broadcast(members) if count <= BROADCAST_ROWS else members, "doc")

    def run(pairs: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        held = {d: np.asarray(s, np.int64) for d, s in zip(members["doc"].tolist(), members["set"], strict=True)}
        keep = []
        for x, y in zip(pairs["x"].tolist(), pairs["y"].tolist(), strict=True):
            a, b = held[x], held[y]
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= percent * (len(a) + len(b) - both))
        give_back()
        return pairs.loc[np.array(keep, bool), ["x", "y"]]

    return rows.select(group, "x", "y").groupBy("cells").cogroup(members.groupBy("cells")).applyInPandas(run, "x long, y long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge (x, y): the smallest node that it is connected with.

    Labels shrink along edges and then jump to their label's label, until none changes; each round ends in stored files.
    """
    seen = Observation()
    edges = stored(edges.select("x", "y").union(edges.select("y", "x")).distinct().observe(seen, F.count(F.lit(1)).alias("n")))
    files = max(4, -(-seen.get["n"] // EDGES_PER_FILE))
    labels = stored(edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low")).select("node", F.least("node", "low").alias("component")).coalesce(files))
    held = labels
    while True:
        near = edges.join(labels.select(F.col("node").alias("y"), "component"), "y").groupBy(F.col("x").alias("node")).agg(F.min("component").alias("low"))
        step = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "low").alias("to"))
        jump = step.join(labels.select(F.col("node").alias("to"), F.col("component").alias("further")), "to", "left")
        new = jump.select("node", "was", F.least("to", F.coalesce("further", "to")).alias("component"))
        seen = Observation()
        new = stored(new.coalesce(files).observe(seen, F.count_if(F.col("was") != F.col("component")).alias("changed")))
        changed = seen.get["changed"]
        drop_stored(held)
        held, labels = new, new.select("node", "component")
        if not changed:
            drop_stored(edges)
            return labels


def block_links(ids: np.ndarray, groups: np.ndarray, sets: list[np.ndarray], asks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join different groups between the sets that ask and the others, all of them in memory."""
    n = np.array([len(s) for s in sets], np.int64)
    others, asking = np.flatnonzero((n > 0) & ~asks), np.flatnonzero((n > 0) & asks)
    if not len(others) or not len(asking):
        return []
    tokens, flat = np.unique(np.concatenate([sets[i] for i in others]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(n[others])])[:-1]
    parent = {g: g for g in groups.tolist()}

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    flag, out = np.zeros(len(tokens), np.bool_), []
    for d in asking.tolist():
        at = np.searchsorted(tokens, sets[d])
        own = at[(at < len(tokens)) & (tokens[np.minimum(at, len(tokens) - 1)] == sets[d])]
        flag[own] = True
        both = np.add.reduceat(flag[flat].astype(np.int64), starts)
        flag[own] = False
        near = np.flatnonzero((100 * both >= percent * (n[others] + n[d] - both)) & (groups[others] != groups[d]))
        for e in others[near].tolist():
            a, b = root(int(groups[d])), root(int(groups[e]))
            if a != b:
                parent[a] = b
                out.append((int(ids[d]), int(ids[e])))
    return out


def _reachable(lists: DataFrame, percent: int) -> DataFrame:
    """Of long lists (token, doc, group, n, ell) what can hold links: (token, size_class, doc, group, n).

    Linked sets differ in size by the factor percent / 100 at most, so they lie in the same or neighbouring classes of a geometric
    scale; each pair of neighbours is a list of its own.  Of a node's lists in a class, e is the least number of matches that it and
    any other node of them need: with fewer than e lists it goes, and else it leaves its e - 1 longest.
    """
    ratio = np.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-9
    size_class = F.floor(F.log("n") / F.lit(float(ratio))).cast("long")
    rows = lists.withColumn("size_class", F.explode(F.array(size_class, size_class + 1)))
    key = ["token", "size_class"]
    sizes = rows.groupBy(*key).agg(F.count("*").alias("length"), F.min("ell").alias("least"))
    own = F.struct("length", "token", F.col("group"))
    rows = rows.join(sizes, key).groupBy("doc", "group", "n", "size_class").agg(F.min(F.least("ell", "least")).alias("e"), F.sort_array(F.collect_list(own)).alias("own"))  # a prefix's tokens at most
    rows = rows.where(F.size("own") >= F.col("e")).select("doc", "group", "n", "size_class", F.explode(F.slice("own", F.lit(1), F.size("own") - F.col("e") + 1)["token"]).alias("token"))
    some = rows.groupBy(*key).agg(F.min("group").alias("a"), F.max("group").alias("b")).where("a <> b")
    return rows.join(some.select(*key), key, "left_semi").select(*key, "doc", "group", "n")


def _merged(lists: DataFrame) -> DataFrame:
    """Lists (token, size_class, doc, group, n), where those that hang together by common nodes become one if that means fewer comparisons.

    The lists of a family of near copies hold nearly the same nodes, whose sets would travel once for each list.
    """
    key = ["token", "size_class"]
    first = lists.groupBy(*key).agg(F.min("group").alias("first"), F.count("*").alias("rows"))
    first = first.join(lists.groupBy(*key, "group").count().groupBy(*key).agg(F.max("count").alias("most")), key).select(*key, "first", (F.col("rows") * (F.col("rows") - F.col("most"))).alias("pairs"))
    hangs = components(lists.select(*key, "group").distinct().join(first, key).select(F.col("group").alias("x"), F.col("first").alias("y")).where("x <> y"))
    nodes = stored(lists.select("doc", "group", "n").distinct().join(hangs.withColumnRenamed("node", "group"), "group"))
    apart = first.join(hangs, F.col("first") == F.col("node")).groupBy("component").agg(F.sum("pairs").alias("apart"))
    by_group = nodes.groupBy("component", "group").agg(F.count("*").alias("rows"))
    together = by_group.groupBy("component").agg(F.sum("rows").alias("rows"), F.max("rows").alias("most"))
    chosen = together.join(apart, "component").where(F.col("rows") * (F.col("rows") - F.col("most")) <= F.col("apart")).select("component")
    one = nodes.join(chosen, "component").select(F.col("component").alias("token"), F.lit(_NO_ID).alias("size_class"), "doc", "group", "n")
    return lists.join(nodes.join(chosen, "component").select("doc"), "doc", "left_anti").select(one.columns).unionByName(one)


def _long_lists(lists: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links between groups in lists (token, size_class, doc, group, n).

    Nodes outside the largest group ask, in blocks, and every block of the list answers: a node of the largest group goes to as many tasks
    as there are blocks of asking nodes, which is one unless these alone fill a block.
    """
    key = ["token", "size_class"]
    by_group = lists.groupBy(*key, "group").agg(F.sum("n").alias("tokens"), F.count("*").alias("rows"))
    of_list = by_group.groupBy(*key).agg(F.sum("tokens").alias("tokens"), F.max(F.struct("rows", "group", "tokens")).alias("largest"))
    blocks = lambda tokens: F.ceil(tokens / F.lit(block)).cast("int")
    of_list = of_list.select(*key, F.col("largest.group").alias("largest"), blocks(F.col("tokens") - F.col("largest.tokens")).alias("asking"), blocks(F.col("tokens")).alias("answering"))
    rows = lists.drop("n").join(of_list, key)
    dealt = lambda c: F.pmod(F.xxhash64("doc", F.lit(c)), F.col(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asks = rows.where("group <> largest").select(*key, "doc", "group", dealt("asking").alias("i"), each("answering").alias("j"), F.lit(True).alias("asks"))
    answers = rows.select(*key, "doc", "group", each("asking").alias("i"), dealt("answering").alias("j"), F.lit(False).alias("asks"))
    rows = asks.unionByName(answers).join(sets, "doc")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = block_links(pdf["doc"].to_numpy(), pdf["group"].to_numpy(), [np.asarray(s, np.int64) for s in pdf["set"]], pdf["asks"].to_numpy(bool), percent)
        give_back()
        return pd.DataFrame(found, columns=["x", "y"], dtype=np.int64)

    return rows.groupBy(*key, "i", "j").applyInPandas(run, "x long, y long")


def jaccard_groups(docs: DataFrame, *, k: int = 3, percent: int = 90, sketch_bits: int = SKETCH_BITS, most: int = MOST_MATCHES, small_list: int = SMALL_LIST, block: int = BLOCK, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs, group (a number of the component's own, null for empty sets) and the
    columns to keep, which are longs."""
    with working() as held:
        first = stored(_first_pass(docs.select("doc_id", "text", *keep), k, sketch_bits))
        sketch = _sketch(first, sketch_bits)
        rows = first.where(F.col("part").isNull()).select("doc_id", *keep, "n", "fp1", "fp2")
        nodes = rows.where("n > 0").groupBy("n", "fp1", "fp2").agg(F.min("doc_id").alias("rep"))
        nodes = stored(nodes.withColumn("doc", F.monotonically_increasing_id()).withColumn("key", F.coalesce("rep", F.lit(_NO_ID))))
        links = _links(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"), "text"), nodes, sketch, k, percent, most, small_list, block)
        names = nodes.select("n", "fp1", "fp2", "rep", F.col("doc").alias("group"))
        if links is not None:
            names = names.join(links.withColumnRenamed("node", "group"), "group", "left").withColumn("group", F.coalesce("component", "group"))
            # the smallest doc_id of a component; most components are one node, whose rep it is
            least = names.where("component is not null").groupBy("group").agg(F.min("rep").alias("least"))
            names = names.join(least, "group", "left").withColumn("rep", F.when(F.col("component").isNull(), F.col("rep")).otherwise(F.col("least")))
        out = rows.join(names.select("n", "fp1", "fp2", "rep", "group"), ["n", "fp1", "fp2"], "left")
        component = F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("rep"))
        return held.keep(stored(out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "group", *keep)))


def _links(docs: DataFrame, nodes: DataFrame, sketch: np.ndarray, k: int, percent: int, most: int, small_list: int, block: int) -> DataFrame | None:
    """Components (node, component) of nodes (doc, and what finds their rows in docs); None without any link."""
    found = _prefix_rows(docs, k, sketch, percent, most).where("n > 0")
    prefix = stored(found.join(nodes.select(*_NAME, "doc"), _NAME).dropDuplicates(_NAME).select("doc", "n", "ell", "tokens"))
    size = prefix.select("doc", "n", "ell")
    entries = prefix.select(F.explode("tokens").alias("token"), "doc")
    lists = entries.groupBy("token").agg(F.count("*").alias("count"), F.min("doc").alias("hub")).where("count > 1")
    entries = stored(entries.join(lists, "token"))

    # each node with the hub that it shares most tokens with, where these are enough for a candidate
    sized = lambda c: size.select(F.col("doc").alias(c), F.col("n").alias(f"n{c}"), F.col("ell").alias(f"ell{c}"))
    hubs = entries.where("doc <> hub").groupBy("doc", "hub").agg(F.count("*").alias("shared")).groupBy("doc").agg(F.max(F.struct("shared", (-F.col("hub")).alias("minus"))).alias("best"))
    pairs = hubs.select(F.col("doc").alias("x"), (-F.col("best.minus")).alias("y"), F.col("best.shared").alias("shared")).join(sized("x"), "x").join(sized("y"), "y")
    close = (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")) & (F.col("shared") >= F.least("ellx", "elly"))
    pairs = stored(pairs.where(close).select("x", "y"))
    named = lambda docs_: docs_.distinct().join(nodes.select("doc", *_NAME), "doc")
    sets = stored(_sets_of(docs, named(pairs.select(F.col("x").alias("doc")).union(pairs.select("y"))), k))
    found = stored(_verified(pairs, sets, size, percent, block, False))
    drop_stored(pairs)
    groups = components(found) if found.limit(1).count() else None

    # lists that still hold more than one group
    grouped = entries.drop("hub")
    if groups is not None:
        grouped = grouped.join(groups.select(F.col("node").alias("doc"), F.col("component").alias("group")), "doc", "left").withColumn("group", F.coalesce("group", "doc"))
    else:
        grouped = grouped.withColumn("group", F.col("doc"))
    mixed = grouped.groupBy("token").agg(F.min("group").alias("a"), F.max("group").alias("b")).where("a <> b").select("token")
    grouped = stored(grouped.join(mixed, "token", "left_semi").join(size, "doc"))
    drop_stored(entries)
    short, long = grouped.where(F.col("count") <= small_list), grouped.where(F.col("count") > small_list)
    in_long = stored(long.groupBy("doc").agg(F.collect_list("token").alias("longs")))  # a prefix's tokens at most
    none = F.expr("cast(array() as array<bigint>)")
    left = short.select("token", *(F.col(c).alias(c + "x") for c in ("doc", "group", "n", "ell")))
    right = short.select("token", *(F.col(c).alias(c + "y") for c in ("doc", "group", "n", "ell")))
    near = (F.col("docx") < F.col("docy")) & (F.col("groupx") != F.col("groupy")) & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
    pairs = left.join(right, "token").where(near).groupBy(F.col("docx").alias("x"), F.col("docy").alias("y"), _least_shared(percent).alias("least")).agg(F.count("*").alias("shared"))
    # what they share in long lists counts as well
    for side in ("x", "y"):
        pairs = pairs.join(in_long.select(F.col("doc").alias(side), F.col("longs").alias("longs" + side)), side, "left")
    both_long = F.size(F.array_intersect(F.coalesce("longsx", none), F.coalesce("longsy", none)))
    pairs = stored(pairs.where(F.col("shared") + both_long >= F.col("least")).select("x", "y"))
    # other pairs share tokens in long lists only, and enough of them
    long = stored(_reachable(long, percent))
    drop_stored(grouped, in_long)
    if long.limit(1).count():
        long = stored(_merged(long))
    extra = pairs.select(F.col("x").alias("doc")).union(pairs.select("y")).union(long.select("doc")).distinct().join(sets.select("doc"), "doc", "left_anti")
    both = sets.unionByName(stored(_sets_of(docs, named(extra), k)))
    # what is linked already stands as a star
    known = found if groups is None else groups.where("node <> component").select(F.col("node").alias("x"), F.col("component").alias("y"))
    every = known.union(stored(_verified(pairs, both, size, percent, block, True)))
    if long.limit(1).count():
        every = every.union(stored(_long_lists(long, both, percent, block)))
    return components(every) if every.limit(1).count() else None


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
