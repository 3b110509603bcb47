"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

Tokens are the text's words with A to Z in lower case, then one end.  The model predicts items: the end, the most frequent
words, and for all other words one of 128 shapes (ending, foreign letters, last letters).  An item's number gives its
class and its place in the class: P(item | history) = P(class | features) * P(place | class, features), two softmaxes of
32.  Features are the word before, the one before that and the third (skips), a hash of the last two words (n-gram), and a bias;
the second softmax's weights are hashed by feature and class.  A word inside a shape takes its share (c + 0.5) of the
shape's training counts, and unseen words together take 0.5: all probabilities sum to one.

Weights are learned by rounds of distributed gradient updates: each task runs Adagrad over its documents from the shared
weights, and the weighted mean of the tasks' weights starts the next round.  Every training document is learned from in one of the rounds;
a task reads its part of the table as a stream, a batch in memory at a time, and texts aren't shuffled; changes are added up in two steps.  Word counts are exact and over all training documents; those
of the most frequent words are broadcast, all others are joined to (word hash, row, count) rows and added up by row.

Rules: null text is the empty text, whose only token is the end; an empty corpus gives an empty result; a null doc_id's fold
is that of ''.  Rows are told apart by their place in the table, so that rows of one doc_id may hold different texts; repeated rows are scored
each and count each.  Texts of any length are read whole, about a megabyte or one longer text in memory at a time.  Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, crc_mod, give_back, hash_words, shared, slices, stored, table, with_row_ids, words, working

#: Words that are counted in arrays; the bound of what is broadcast.
HEAD = 100_000
SHAPES, SIDE = 128, 32
ITEMS = SIDE * SIDE
BEGIN = ITEMS
#: Weight rows of the two softmaxes; the first has a bias, the three words before, and hashed pairs of the last two.
PAIRS = 8192
_WORD1, _WORD2, _WORD3, _PAIR = (1 + k * (ITEMS + 1) for k in range(4))
ROWS1, ROWS2 = _PAIR + PAIRS, 1 << 15
ROUNDS, BATCH, RATE = 3, 4096, 0.3
#: Training documents per task.
TASK_DOCS = 2000
#: What scoring finds in a row on its own.
_LOCAL = "doc_id long, train boolean, file long, row long, n_tokens long, known long, own double, model double"
#: Weights in a piece that travels alone.
_PIECE = 1 << 16


def tokens(text: str | None) -> list[str]:
    if not text:
        return []
    return words(text if text.islower() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def shape(word: str) -> int:
    """0 to 127: the kind of the last character, the first letter beyond ASCII, and the last two letters, hashed."""
    if word and word[-1] in ".,;:!?":
        core, ending = word.rstrip(".,;:!?"), 1 if word[-1] == "." else 2 if word[-1] == "," else 3
    else:
        core, ending = word, 0
    foreign = 0 if word.isascii() else 1 + ord(next(c for c in word if c > "\x7f")) % 3
    return (ending * 4 + foreign) * 8 + (ord(core[-2:][0]) * 7 % 8 if core else 0)


class Words:
    """What is known of words: index in the head (0 is the end, -1 outside), item, shape; unknown ones are worked out."""

    def __init__(self, head: list[str]):
        self.head = {w: i + 1 for i, w in enumerate(head)}
        self.top = ITEMS - SHAPES - 1
        self.shapes = np.full(len(head) + 1, -1, np.int64)  # of head words, once they have been asked for

    def look_up(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(document, code) of each word, the distinct words, and their head index, item and shape."""
        count = np.array([len(ws) for ws in split], np.int64)
        code, unique = pd.factorize(np.array([w for ws in split for w in ws], dtype=object))
        unique = list(unique)
        index = np.fromiter((self.head.get(w, -1) for w in unique), np.int64, len(unique))
        shapes = np.where(index < 0, -1, self.shapes[np.maximum(index, 0)])
        new = np.flatnonzero(shapes < 0)
        shapes[new] = np.fromiter((shape(unique[i]) for i in new.tolist()), np.int64, len(new))
        self.shapes[index[new[index[new] > 0]]] = shapes[new[index[new] > 0]]
        item = np.where((index > 0) & (index <= self.top), SHAPES + index, 1 + shapes)
        return np.repeat(np.arange(len(split)), count), code, unique, index, item, shapes


def _sequence(doc: np.ndarray, item: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents' items, each followed by the end: (document, target item, features)."""
    size = np.bincount(doc, minlength=n) + 1
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    total = int(size.sum())
    target = np.zeros(total, np.int64)  # item 0 is the end
    of = np.repeat(np.arange(n), size)
    at = np.arange(total) - start[of]
    target[np.arange(len(item)) + doc] = item
    back = []
    for k in (1, 2, 3):
        b = np.full(total, BEGIN, np.int64)
        b[k:] = target[:-k]
        b[at < k] = BEGIN
        back.append(b)
    a, b, c = back
    pair = (a * 40503 + b * 10007 + (a * b) % 8191) & (PAIRS - 1)
    return of, target, np.stack([np.zeros(total, np.int64), _WORD1 + a, _WORD2 + b, _WORD3 + c, _PAIR + pair], 1)


def _second(features: np.ndarray, klass: np.ndarray) -> np.ndarray:
    """Rows of the second table; the bias has rows of its own, one per class.  16 bits are enough, as ROWS2 divides what they wrap at."""
    f, k = features.astype(np.uint16), klass.astype(np.uint16)[:, None]
    out = f * (k * np.uint16(31) + np.uint16(2654435761 % (1 << 16)))
    out += k * np.uint16(40503)
    out &= np.uint16(ROWS2 - 1)
    out[:, 0] = ROWS2 + klass
    return out


def _exp(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """z, made smaller by each line's maximum where float32 could overflow or vanish, and exp of it."""
    if not (-60 < z.min(initial=0) and z.max(initial=0) < 60):
        z = z - z.max(1, keepdims=True)
    return z, np.exp(z)


_ONES = np.ones(SIDE, np.float32)


def _log_softmax_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each line's log softmax at one place."""
    z, e = _exp(z)
    return z[np.arange(len(at)), at] - np.log(e @ _ONES)


def _summed(table_: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """table_[rows].sum(1), a column of rows at a time."""
    z = table_.take(rows[:, 0], 0)
    for k in range(1, rows.shape[1]):
        z += table_.take(rows[:, k], 0)
    return z


def _added(p: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in rows, and for each the sum of p over the lines that name it, as often as they do.

    First, second, ... lines are added for all numbers at once, the most frequent ones first; these add the rest on their own.
    """
    flat = rows.ravel().astype(np.uint16)  # numbers of rows fit, and so short ones are sorted by radix
    line = np.argsort(flat, kind="stable")
    flat = flat[line]
    line //= rows.shape[1]
    first = np.concatenate([[0], np.flatnonzero(flat[1:] != flat[:-1]) + 1])
    size = np.diff(first, append=len(flat))
    by = np.argsort(-size, kind="stable")
    first, size = first[by], size[by]
    out = p.take(line[first], 0)
    k, more = 1, int((size > 1).sum())
    while more > 50:
        out[:more] += p.take(line[first[:more] + k], 0)
        k += 1
        more = int((size[:more] > k).sum())
    for i in range(more):
        out[i] += p.take(line[first[i] + k : first[i] + size[i]], 0).sum(0)
    return flat[first].astype(np.int64), out


class Weights:
    def __init__(self, one: np.ndarray | None = None, two: np.ndarray | None = None):
        self.one = np.zeros((ROWS1, SIDE), np.float32) if one is None else one
        self.two = np.zeros((ROWS2 + SIDE, SIDE), np.float32) if two is None else two

    def log10(self, target: np.ndarray, features: np.ndarray, batch: int = 16_384) -> np.ndarray:
        """log10 P(target item | features)."""
        out = np.empty(len(target))
        for a in range(0, len(target), batch):
            t, f = target[a : a + batch], features[a : a + batch]
            klass, place = t % SIDE, t // SIDE
            out[a : a + batch] = _log_softmax_at(_summed(self.one, f), klass) + _log_softmax_at(_summed(self.two, _second(f, klass)), place)
        return out / np.log(10)

    def learn(self, target: np.ndarray, features: np.ndarray, squares: list[np.ndarray], rate: float) -> None:
        """One Adagrad step on a batch."""
        klass, place = target % SIDE, target // SIDE
        for which, table_, rows, right in ((0, self.one, features, klass), (1, self.two, _second(features, klass), place)):
            p = _exp(_summed(table_, rows))[1]
            p /= (p @ _ONES)[:, None]
            p[np.arange(len(right)), right] -= 1
            at, slope = _added(p, rows)
            slope *= np.float32(1 / np.sqrt(len(right)))
            square = squares[which].take(at, 0)
            square += slope * slope
            squares[which][at] = square
            square += np.float32(1e-6)
            slope /= np.sqrt(square, out=square)
            slope *= np.float32(rate)
            table_[at] = np.subtract(table_.take(at, 0), slope, out=slope)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.one.ravel(), self.two.ravel()])

    def pieces(self) -> list[bytes]:
        flat = self.flat().astype(np.float16).tobytes()
        return [flat[a : a + _PIECE] for a in range(0, len(flat), _PIECE)]

    @classmethod
    def join(cls, pieces: list[bytes]) -> Weights:
        flat = np.frombuffer(b"".join(pieces), np.float16).astype(np.float32)
        cut = ROWS1 * SIDE
        return cls(flat[:cut].reshape(ROWS1, SIDE).copy(), flat[cut:].reshape(-1, SIDE).copy())


def count_words(docs: DataFrame) -> DataFrame:
    """Each word of docs with its count n and its level (a quarter of a power of two), stored."""

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for text in column(part, "text"):
                    seen.update(tokens(text))
            if len(seen) > 4 * HEAD:
                yield _counted(seen)
                seen = Counter()
        yield _counted(seen)
        give_back()

    found = docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(found.withColumn("level", F.floor(4 * F.log2("n")).cast("int")))


def choose_head(counts: DataFrame, most: int = HEAD) -> tuple[list[str], list[int]]:
    """The most frequent words of count_words(), at most so many, and their counts; cut where words get rarer by a level, so that only
    these reach the driver; which ones decides the items and how much is shuffled, no count depends on it."""
    total, least = 0, None
    for r in counts.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        if (total := total + r.words) > most:
            break
        least = r.level
    kept = counts.orderBy(F.desc("n"), "word").limit(most) if least is None else counts.where(F.col("level") >= least)
    chosen = sorted(kept.select("word", "n").collect(), key=lambda r: (-r.n, r.word))
    return [r.word for r in chosen], [r.n for r in chosen]


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def train(docs: DataFrame, head: list[str], *, rounds: int = ROUNDS, rate: float = RATE) -> Weights:
    """Distributed gradient updates over docs (doc_id, text), each of them in one of the rounds."""
    spark, weights = docs.sparkSession, Weights()
    tasks = max(2, -(-docs.count() // (rounds * TASK_DOCS)))
    steps = math.isqrt(tasks) + 1

    def run_with(known, held):
        def run(batches):
            own, lookup = Weights.join(held.value), Words(known.value)
            squares, seen = [np.zeros_like(own.one), np.zeros_like(own.two)], 0
            for batch in batches:
                for part in slices(batch, most=500_000):
                    split = [tokens(t) for t in column(part, "text")]
                    doc, code, _, _, item, _ = lookup.look_up(split)
                    _, target, features = _sequence(doc, item[code], len(split))
                    mixed = np.random.default_rng(len(target)).permutation(len(target))
                    for a in range(0, len(target), BATCH):
                        own.learn(target[mixed[a : a + BATCH]], features[mixed[a : a + BATCH]], squares, rate)
                    seen += len(target)
            if seen:  # what changed, weighted by the tokens learned from; untouched pieces aren't sent
                start = Weights.join(held.value)
                change = (seen * (own.flat() - start.flat()).astype(np.float64)).astype(np.float32)
                made = [(i, pa.compress(c.tobytes(), codec="zstd", asbytes=True)) for i, a in enumerate(range(0, len(change), _PIECE)) if (c := change[a : a + _PIECE]).any()]
                made.append((-1, np.float64(seen).tobytes()))
                step = TaskContext.get().partitionId() % steps
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in made], pa.int32()), pa.array([step] * len(made), pa.int32()), pa.array([b for _, b in made], pa.binary())], ["piece", "step", "change"])
            give_back()

        return run

    def add(first: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            piece, total = int(pdf["piece"].iloc[0]), 0.0
            size = 4 * min(_PIECE, (ROWS1 + ROWS2 + SIDE) * SIDE - piece * _PIECE)
            for c in pdf["change"]:
                c = np.frombuffer(pa.decompress(c, size, "zstd"), np.float32) if first and piece >= 0 else np.frombuffer(c, np.float64)
                total = total + c.astype(np.float64)
            return pd.DataFrame({"piece": [piece], "step": [0], "change": [total.tobytes()]})

        return run

    shape = "piece int, step int, change binary"
    for r in range(rounds):
        with working():
            part = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(rounds)) == r)
            changes = part.coalesce(tasks).mapInArrow(run_with(shared(spark, head), shared(spark, weights.pieces())), shape)
            # about the root of the tasks' number in a group
            summed = stored(changes.groupBy("piece", "step").applyInPandas(add(True), shape).groupBy("piece").applyInPandas(add(False), shape))
            done = {d.piece: np.frombuffer(bytes(d.change), np.float64) for d in summed.collect()}
        if -1 in done:
            flat = Weights.join(weights.pieces()).flat().astype(np.float64)
            for i, change in done.items():
                if i >= 0:
                    flat[i * _PIECE : i * _PIECE + len(change)] += change / done[-1][0]
            weights = Weights.join([flat.astype(np.float16).tobytes()])
    return weights


def _keys(words_: list[str], shapes: np.ndarray) -> np.ndarray:
    """Hashes of words outside the head, with their shapes in the low bits."""
    return ((hash_words(words_) & ~np.uint64(SHAPES - 1)) | shapes.astype(np.uint64)).view(np.int64)


def _outside(counts: DataFrame, head: list[str]) -> DataFrame:
    """key, shape and n of the words of count_words() that aren't in the head."""
    known = shared(counts.sparkSession, head)

    def run(batches):
        inside = set(known.value)
        for batch in batches:
            word, n = column(batch, "word"), batch.column(batch.schema.get_field_index("n"))
            rest = np.array([i for i, w in enumerate(word) if w not in inside], np.int64)
            word = [word[i] for i in rest.tolist()]
            shapes = np.fromiter(map(shape, word), np.int64, len(word))
            yield pa.RecordBatch.from_arrays([pa.array(_keys(word, shapes)), pa.array(shapes), n.take(pa.array(rest))], ["key", "shape", "n"])

    return counts.select("word", "n").mapInArrow(run, "key long, shape long, n long")


def _rest_of_rows(local: DataFrame, outside: DataFrame) -> DataFrame:
    """Per row (file, row) of local, over its words outside the head (keys, times): the sum of times * log10(c + 0.5) and how many are known.
    Counts are added up before they are joined back, so that no task holds all rows of a word."""
    rows = local.select("file", "row", F.explode(F.arrays_zip("keys", "times")).alias("at")).select("file", "row", F.col("at.keys").alias("key"), F.col("at.times").alias("n"))
    counts = outside.groupBy("key").agg(F.sum("n").alias("c"))
    n, c = F.col("n"), F.coalesce("c", F.lit(0))
    return rows.join(counts, "key", "left").groupBy("file", "row").agg(F.sum(n * F.log10(c + 0.5)).alias("terms"), F.sum(F.when(c > 0, n).otherwise(0)).alias("more"))


def score(docs: DataFrame, fold: Column, *, head_words: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; fold holds for held-out rows of docs."""
    with working() as held:
        docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (~fold).alias("train"))
        docs = with_row_ids(docs)
        return held.keep(stored(_scored(docs, head_words)))


def _scored(docs: DataFrame, head_words: int) -> DataFrame:
    learned = docs.where("train").select("doc_id", "text")
    counts = count_words(learned)
    head, n_head = choose_head(counts, head_words)
    weights = train(learned, head)

    outside = stored(_outside(counts, head))
    heads, shapes, kinds = np.array([learned.count(), *n_head], float), np.zeros(SHAPES), np.zeros(SHAPES)
    for r in outside.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        shapes[r["shape"]], kinds[r["shape"]] = r["n"], r["kinds"]
    n_tokens, n_kinds = heads.sum() + shapes.sum(), (heads > 0).sum() + kinds.sum()
    lookup = Words(head)
    room = shapes + 0.5 * kinds + 0.5
    for i, w in enumerate(head[lookup.top :], lookup.top + 1):
        if heads[i] > 0:
            room[shape(w)] += heads[i] + 0.5
    known = shared(docs.sparkSession, (head, weights.pieces(), heads, np.log10(room)))

    def run(batches):
        head, pieces, heads, log_room = known.value
        lookup, weights = Words(head), Weights.join(pieces)
        log_heads = np.log10(heads + 0.5)
        for batch in batches:
            for part in slices(batch, most=1_000_000):
                split = [tokens(t) for t in column(part, "text")]
                doc, code, unique, index, item, shapes = lookup.look_up(split)
                size = len(split)
                of, target, features = _sequence(doc, item[code], size)
                model = np.bincount(of, weights.log10(target, features), minlength=size)
                in_head = index > 0
                own = np.where(in_head, log_heads[np.maximum(index, 0)], 0.0)
                inside = np.where(item > SHAPES, 0.0, own - log_room[shapes])
                sure = in_head & (heads[np.maximum(index, 0)] > 0)
                sums = [np.bincount(doc, v[code], minlength=size) for v in (own, inside, sure.astype(float))]
                rest = index[code] < 0
                at, times = np.unique(doc[rest] * len(unique) + code[rest], return_counts=True)
                of_doc, at = at // max(1, len(unique)), at % max(1, len(unique))
                need = np.flatnonzero(index < 0)
                key = np.zeros(len(unique), np.int64)
                key[need] = _keys([unique[i] for i in need.tolist()], shapes[need])
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of_doc, minlength=size))]).astype(np.int32))
                get = lambda name: part.column(part.schema.get_field_index(name))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        get("doc_id").cast(pa.int64()), get("train"), get("file"), get("row"), pa.array(np.bincount(of, minlength=size).astype(np.int64)),
                        pa.array(sums[2].astype(np.int64) + int(heads[0] > 0)), pa.array(sums[0] + log_heads[0]), pa.array(model + sums[1]),
                        pa.ListArray.from_arrays(ends, pa.array(key[at])), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64))),
                    ],
                    ["doc_id", "train", "file", "row", "n_tokens", "known", "own", "model", "keys", "times"],
                )
        give_back()

    local = stored(docs.mapInArrow(run, f"{_LOCAL}, keys array<long>, times array<long>"))
    terms = F.coalesce("terms", F.lit(0.0))
    return local.drop("keys", "times").join(_rest_of_rows(local, outside), ["file", "row"], "left").select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(n_tokens)).cast("long").alias("train_tokens"),
        (F.col("own") + terms - F.col("n_tokens") * F.lit(float(np.log10(n_tokens + 0.5 * (n_kinds + 1))))).alias("base_score"),
        (F.col("model") + terms).alias("score"),
    )


def op4_maxent_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 1)
