"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

Frequent words (the tokenizer's own whole words, in the order in which its training found them) are compiled into a minimal acyclic
automaton that shares suffixes.  Each transition carries the number of words that sort before those it leads to, so that the sum along
a path is the word's rank, and the rank addresses the word's ids in one flat array.  The automaton is a few megabytes
(bounded by `lexicon_words`); it is broadcast, written once per Python worker to an unlinked file and memory-mapped.
Words outside it are merged exactly, lowest merge rank first.

Rules: null text is the empty text and has no ids; the strings of added tokens are found first and give their own ids;
other stretches are normalised, split and merged.  Texts and words of any length are read whole (long words merge by a
heap, near-linearly); an empty table gives an empty one.  Equal texts give equal rows; repeated rows stay repeated.  The tokenizer
file is read by the driver only; where the standard library's rules may differ, workers ask the tokenizers library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from contextlib import suppress
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from .common import column, give_back, shared, slices, table

#: How many words the lexicon holds at most.
LEXICON_WORDS = 30_000
#: Words that a Python worker remembers at most.
REMEMBERED = 100_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Beyond these code points the library's own normaliser and splitter are asked, since Unicode versions may differ.
_PLAIN = re.compile("[\x00-\u024f\u2010-\u2027\u2030-\u205e]*\\Z")
#: The split pattern for such texts, in classes of the standard library's faster engine, to which U+001C to U+001F are
#: white space, but not to the library.
_PLAIN_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_\xb2\xb3\xb9\xbc-\xbe]+|[\\d\xb2\xb3\xb9\xbc-\xbe]|(?:[^\\s\\w]|[_\x1c-\x1f])+")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable stand-in of every byte: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in same else extra))
        extra += b not in same
    return out


@dataclass
class Rules:
    """A tokenizer file's contents in the form that merging needs."""

    spec: str  # the file's text: what executors need of it travels with it
    pattern: str
    tokens: list[str]
    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    added: dict[str, int]
    end: str

    @classmethod
    def load(cls, path: str) -> Rules:
        """Reads the file where the driver runs; executors get its text."""
        with open(path, encoding="utf-8") as f:
            text = f.read()
        spec = json.loads(text)
        model = spec["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in (model["vocab"] | added).items()}
        return cls(text, spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"], [names.get(i, "") for i in range(max(names) + 1)], model["vocab"], {p: r for r, p in enumerate(pairs)}, added, model["end_of_word_suffix"] or "")

    def __post_init__(self):
        n = len(self.tokens)
        pairs = sorted((self.ids[a] * n + self.ids[b], r, self.ids[a + b]) for (a, b), r in self.ranks.items())
        self.keys = np.array([k for k, _, _ in pairs], np.int64)
        self.scores = np.array([r * n + i for _, r, i in pairs], np.int64)  # by rank; the remainder is the merged token
        self.quick = dict(zip(self.keys.tolist(), self.scores.tolist(), strict=True))
        letters = byte_letters()
        self.inner = np.array([self.ids[c] for c in letters], np.int64)
        self.last = np.array([self.ids[c + self.end] for c in letters], np.int64)
        self.ids, self.ranks = {}, {}  # not needed any more, and workers would hold them

    def merge(self, word: str) -> list[int]:
        """The ids of one word: the pair of lowest rank, leftmost first, is merged until none is left.  A heap of pairs
        over a linked list keeps very long words near-linear."""
        raw = word.encode("utf-8")
        parts = [int(self.inner[b]) for b in raw[:-1]] + [int(self.last[raw[-1]])]
        n, quick, size = len(self.tokens), self.quick, len(parts)
        after, before = [*range(1, size), -1], [*range(-1, size - 1)]
        heap = [(s, i, parts[i], parts[i + 1]) for i in range(size - 1) if (s := quick.get(parts[i] * n + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            score, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = score % n, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (s := quick.get(parts[x] * n + parts[y])) is not None:
                    heapq.heappush(heap, (s, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def _pair_scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * len(self.tokens) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.scores[at], _NONE)

    def merge_many(self, words: list[str]) -> list[list[int]]:
        """merge() for many words at once: each step merges the best pair of every word that still has one."""
        raw = [w.encode("utf-8") for w in words]
        size = np.array([len(r) for r in raw])
        out: list = [None] * len(raw)
        for i in np.flatnonzero(size > 32):
            out[i] = self.merge(words[i])
        order = np.flatnonzero(size <= 32)
        order = order[np.argsort(size[order], kind="stable")]
        for block in np.array_split(order, max(1, len(order) // 4000)):
            if not len(block):
                continue
            width = int(size[block].max())
            bytes_ = np.frombuffer(b"".join(raw[i].ljust(width, b"\0") for i in block), np.uint8).reshape(len(block), width)
            at, ends = np.arange(width)[None, :], size[block][:, None]
            ids = np.where(at < ends - 1, self.inner[bytes_], np.where(at == ends - 1, self.last[bytes_], -1))
            scores = np.concatenate([self._pair_scores(ids[:, :-1], ids[:, 1:]), np.full((len(block), 1), _NONE)], 1)
            rows = np.arange(len(block))
            while len(rows):
                now = scores[rows]
                i = now.argmin(1)
                best = now[np.arange(len(rows)), i]
                live = best < _NONE
                rows, i, best, now = rows[live], i[live], best[live], now[live]
                if not len(rows):
                    break
                k = np.arange(len(rows))
                shift = np.minimum(at + (at > i[:, None]), width - 1)  # what follows the pair moves one to the left
                part = np.take_along_axis(ids[rows], shift, 1)
                part[:, -1] = np.where(i == width - 1, part[:, -1], -1)
                part[k, i] = best % len(self.tokens)
                now = np.take_along_axis(now, shift, 1)
                now[:, -1] = _NONE
                now[k, i] = self._pair_scores(part[k, i], np.where(i + 1 < width, part[k, np.minimum(i + 1, width - 1)], -1))
                left = np.flatnonzero(i > 0)
                now[left, i[left] - 1] = self._pair_scores(part[left, i[left] - 1], part[left, i[left]])
                ids[rows], scores[rows] = part, now
            for i, row in zip(block, ids.tolist(), strict=True):
                out[i] = row[: row.index(-1)] if row[-1] == -1 else row
        return out


_NONE = np.int64(1) << 60
_LETTERS: list[str] = []


def _letters() -> list[str]:
    if not _LETTERS:
        _LETTERS.extend(byte_letters())
    return _LETTERS


class Splitter:
    """Texts to words: added tokens, then normalisation, then the split pattern."""

    def __init__(self, rules: Rules):
        self.find = _PLAIN_SPLIT.findall if rules.pattern == _PATTERN else regex.compile(rules.pattern, regex.V0).findall
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(rules.added, key=len, reverse=True))) + ")") if rules.added else None
        self.spec, self.library = rules.spec, None

    def odd(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.spec)
            self.back = {c: b for b, c in enumerate(_letters())}
        text = self.library.normalizer.normalize_str(text)
        return [bytes(self.back[c] for c in w).decode("utf-8") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def plain(self, text: str) -> list[str]:
        if not text.isascii():
            if not _PLAIN.match(text):
                return self.odd(text)
            text = unicodedata.normalize("NFC", text)
            if not _PLAIN.match(text) or "İ" in text:
                return self.odd(text)
        return self.find(text.lower())

    def __call__(self, text: str) -> list[tuple[bool, list[str]]]:
        """Stretches as (is an added token, words)."""
        if self.added is None or "<" not in text:
            return [(False, self.plain(text))] if text else []
        return [(bool(i % 2), [part] if i % 2 else self.plain(part)) for i, part in enumerate(self.added.split(text)) if part]


class Lexicon:
    """A minimal acyclic automaton over byte strings whose paths number the words in sorted order."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, before: np.ndarray, final: np.ndarray, start: int, offsets: np.ndarray, ids: np.ndarray):
        self.keys, self.targets, self.before, self.final, self.start, self.offsets, self.ids = keys, targets, before, final, start, offsets, ids

    @classmethod
    def build(cls, entries: dict[str, list[int]]) -> Lexicon:
        """Incremental construction over sorted words: when a word leaves the previous one's path, the part of that path
        below the common prefix can no longer change, and each of its states is replaced by an equal one if there is any."""
        named = sorted((w.encode("utf-8"), ids) for w, ids in entries.items())
        register: dict[tuple, int] = {}
        frozen: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        path: list[list] = [[False, []]]  # open states: [final, [(byte, state or None while open)]]

        def freeze(state: list) -> int:
            key = (state[0], tuple(state[1]))
            if key not in register:
                register[key] = len(frozen)
                frozen.append(key)
            return register[key]

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                number = freeze(path.pop())
                byte, _ = path[-1][1][-1]
                path[-1][1][-1] = (byte, number)

        last = b""
        for word, _ in named:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            close(common)
            for byte in word[common:]:
                path[-1][1].append((byte, -1))
                path.append([False, []])
            path[-1][0] = True
            last = word
        close(0)
        start = freeze(path[0])
        below = np.zeros(len(frozen), dtype=np.int64)
        keys, targets, before = [], [], []
        for number, (final, edges) in enumerate(frozen):  # targets are frozen before their sources
            total = int(final)
            for byte, target in edges:
                keys.append(number * 256 + byte)
                targets.append(target)
                before.append(total)
                total += below[target]
            below[number] = total
        offsets = np.cumsum([0, *(len(ids) for _, ids in named)])
        flat = [i for _, ids in named for i in ids]
        return cls(np.array(keys, np.int64), np.array(targets, np.int32), np.array(before, np.int32), np.array([f for f, _ in frozen], np.bool_), start, offsets.astype(np.int32), np.array(flat, np.uint32))

    def dump(self) -> bytes:
        arrays = [np.array([self.start], np.int64), self.keys, self.targets, self.before, self.final, self.offsets, self.ids]
        head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
        body = b"".join(b.ljust(-(-len(b) // 8) * 8, b"\0") for b in (a.tobytes() for a in arrays))
        return len(head).to_bytes(8, "little") + head.ljust(-(-len(head) // 8) * 8) + body

    @classmethod
    def map(cls, data: bytes) -> Lexicon:
        """Write to a file without a name and map it: the pages can be dropped and shared, and nothing is left behind."""
        with tempfile.TemporaryFile() as f:
            f.write(data)
            f.flush()
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n = int.from_bytes(view[:8], "little")
        at, arrays = 8 + -(-n // 8) * 8, []
        for kind, count in json.loads(view[8 : 8 + n]):
            arrays.append(np.frombuffer(view, np.dtype(kind), count, at))
            at += -(-arrays[-1].nbytes // 8) * 8
        return cls(*arrays[1:5], int(arrays[0][0]), *arrays[5:])

    def look_up(self, words: list[str]) -> list[np.ndarray | None]:
        """The ids of each word, None for words outside; all words step through the automaton together."""
        raw = [w.encode("utf-8") for w in words]
        size = np.array([len(r) for r in raw])
        if not len(self.keys) or not len(raw):
            return [None] * len(raw)
        alive = np.flatnonzero((size > 0) & (size <= 64))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        state, rank = np.full(len(raw), self.start, np.int64), np.zeros(len(raw), np.int64)
        done = np.zeros(len(raw), np.bool_)
        step = 0
        while len(alive):
            key = state[alive] * 256 + flat[first[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[at] == key
            alive, at = alive[there], at[there]
            state[alive] = self.targets[at]
            rank[alive] += self.before[at]
            step += 1
            over = size[alive] == step
            ended = alive[over]
            done[ended] = self.final[state[ended]]
            alive = alive[~over]
        return [self.ids[self.offsets[r] : self.offsets[r + 1]] if ok else None for r, ok in zip(rank, done, strict=True)]


class Encoder:
    """Texts to ids and back, with a bounded memory of words."""

    def __init__(self, rules: Rules, lexicon: Lexicon | None):
        self.rules, self.lexicon, self.split = rules, lexicon, Splitter(rules)
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}

    def _keep(self, word: str, ids) -> None:
        tokens = self.rules.tokens
        self.ids[word] = struct.pack(f"<{len(ids)}I", *ids)
        self.texts[word] = " ".join([tokens[i] for i in ids])

    def learn(self, words: set[str]) -> None:
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.texts.clear()
        new = [w for w in words if w not in self.ids]
        found = self.lexicon.look_up(new) if self.lexicon else [None] * len(new)
        unseen = [w for w, ids in zip(new, found, strict=True) if ids is None]
        for word, ids in zip(unseen, self.rules.merge_many(unseen), strict=True):
            self._keep(word, ids)
        for word, ids in zip(new, found, strict=True):
            if ids is not None:
                self._keep(word, ids.tolist())

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """For each text its ids as little-endian unsigned 32-bit integers, and the decoded text: the tokens' strings
        joined by spaces, as a tokenizer file without a decoder has it."""
        parts = [self.split(t) if t else [] for t in texts]
        self.learn({w for stretches in parts for added, ws in stretches if not added for w in ws})
        get, say, added_ids, out = self.ids.__getitem__, self.texts.__getitem__, self.rules.added, []
        for stretches in parts:
            if len(stretches) == 1 and not stretches[0][0]:
                ws = stretches[0][1]
                out.append((b"".join(map(get, ws)), " ".join(map(say, ws))))
                continue
            ids, said = [], []
            for added, ws in stretches:
                ids += [added_ids[ws[0]].to_bytes(4, "little")] if added else map(get, ws)
                said += ws if added else map(say, ws)
            out.append((b"".join(ids), " ".join(said)))
        return out


def whole_words(rules: Rules, most: int) -> list[str]:
    """The first words that are tokens of their own: a tokenizer numbers them by how frequent its training found them."""
    back, out = {c: b for b, c in enumerate(byte_letters())}, []
    for token in rules.tokens:
        if len(out) < most and token.endswith(rules.end) and len(token) > len(rules.end):
            with suppress(KeyError, UnicodeDecodeError):  # added tokens, parts of characters
                out.append(bytes(back[c] for c in token[: len(token) - len(rules.end)]).decode("utf-8"))
    return out


def encode_documents(docs: DataFrame, path: str, *, lexicon_words: int = LEXICON_WORDS, ids: bool = False, texts: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Encode and decode every whole text of docs (doc_id, text; other columns but those to keep are ignored).

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 per row; with ids=True also ids array<int>, with texts=True also
    decoded string, and the columns to keep at the end.
    """
    docs = docs.select("doc_id", "text", *keep)
    rules = Rules.load(path)
    held = shared(docs.sparkSession, (rules, Lexicon.build({w: rules.merge(w) for w in whole_words(rules, lexicon_words)}).dump()))

    def run(batches):
        encoder = _encoder(held)
        for batch in batches:
            for part in slices(batch):
                made = encoder.encode(column(part, "text"))
                arrays = [
                    part.column(0).cast(pa.int64()),
                    pa.array([len(i) // 4 for i, _ in made], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i, _ in made]),
                    pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for _, d in made]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    ends = np.cumsum([0, *(len(i) // 4 for i, _ in made)], dtype=np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(i for i, _ in made), "<i4"))))
                    names.append("ids")
                if texts:
                    arrays.append(pa.array([d for _, d in made], pa.string()))
                    names.append("decoded")
                arrays.extend(part.column(part.schema.get_field_index(k)) for k in keep)
                names.extend(keep)
                yield pa.RecordBatch.from_arrays(arrays, names)
        give_back()

    return docs.mapInArrow(run, SCHEMA + (", ids array<int>" if ids else "") + (", decoded string" if texts else "") + "".join(f", {k} {t}" for k, t in docs.dtypes[2:]))


_ENCODERS: dict[int, Encoder] = {}


def _encoder(held: Broadcast) -> Encoder:
    """One encoder per Python worker and broadcast."""
    key = id(held.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        rules, data = held.value
        _ENCODERS[key] = Encoder(rules, Lexicon.map(data))
    return _ENCODERS[key]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())
