"""Language identification by prediction by partial matching over bytes.

Per language a tree of byte contexts up to three bytes long predicts the next byte.  A context gives a byte it has seen
c times the share c/(T+D) (T bytes seen, D different ones) and keeps D/(T+D) for escaping to the next shorter context,
where bytes that the longer one could code are excluded; below the empty context all 256 bytes are alike.  After training
the statistics are frozen: per language sorted arrays hold the exact code length of every byte string learned and what every
context's escape adds, so the code length of any four bytes is found by four searches.  A text is taken apart into its
different four-byte strings, each is coded once per language, and the sums are taken in numpy, a megabyte at a time.

What is coded: the text's lower-case form in UTF-8, each run of ASCII non-letters as one space.  The language with the
shortest code wins (ties: the first by name); score is its posterior under equal priors.

Learning uses at most `docs_per_lang` documents of each language in expectation (those with the lowest hashes of doc_id),
whole texts, and keeps the `grams_per_lang` most frequent four-byte strings of each: about a megabyte a language, however many
languages there are.  Rules: null texts and texts without a letter are `und` with score 0; with nothing to learn from, all
texts are.  Texts of any length are read whole; rows stay as they are, repeated ones too; columns beyond doc_id, text and lang are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, crc_mod, give_back, shared, slices, table

DOCS_PER_LANG = 1500
#: Four-byte strings kept of each language.
GRAMS_PER_LANG = 75_000
#: Bytes that are coded at a time, in memory.
_CHUNK = 1 << 18
_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def coded(text: str) -> np.ndarray:
    """The bytes that are coded: three spaces, then the folded text; empty if the text has no letter."""
    raw = text.lower().encode("utf-8", "replace").translate(_FOLD)
    b = np.frombuffer(b"   " + raw, np.uint8)
    keep = np.ones(len(b), np.bool_)
    keep[4:] = (b[4:] != 32) | (b[3:-1] != 32)
    b = b[keep]
    if len(b) <= 4 and not (b[3:] != 32).any():
        return b[:0]
    if not ((b >= 97) & (b <= 122)).any() and not any(c.isalpha() for c in text):
        return b[:0]
    return b


def _grams(b: np.ndarray) -> np.ndarray:
    """Each coded byte with the three before it, as one number; the latest byte is the lowest."""
    w = b.astype(np.uint32)
    return (w[:-3] << 24) | (w[1:-2] << 16) | (w[2:-1] << 8) | w[3:]


@dataclass
class Language:
    """One language's frozen statistics; by order, the number of bytes of context."""

    strings: list[np.ndarray]  # context and byte, as one number, sorted
    cost: list[np.ndarray]  # their code lengths in nats
    contexts: list[np.ndarray]  # sorted
    escape: list[np.ndarray]  # nats that a byte unknown to the context costs besides its code in the shorter context

    @classmethod
    def freeze(cls, gram: np.ndarray, n: np.ndarray) -> Language:
        """From counts n of four-byte strings."""
        out, shorter = cls([], [], [], []), None
        for order in range(4):
            strings, place = np.unique(gram & _mask(order + 1), return_inverse=True)
            count = np.bincount(place, n, len(strings))
            contexts, of = np.unique(strings >> 8, return_inverse=True)
            total, kinds = np.bincount(of, count), np.bincount(of)
            share = count / (total + kinds)[of]
            below = np.full(len(strings), 1 / 256) if shorter is None else shorter[np.searchsorted(out.strings[-1], strings & _mask(order))]
            left = np.maximum(1 - np.bincount(of, below), 1e-9)
            out.strings.append(strings.astype(np.uint32))
            out.cost.append(-np.log(share))
            out.contexts.append(contexts.astype(np.uint32))
            out.escape.append(np.log(left) - np.log(kinds / (total + kinds)))
            shorter = share
        return out

    def code(self, gram: np.ndarray) -> np.ndarray:
        """Nats of the last byte of each four-byte string (unsigned 32-bit, sorted), after the first three."""
        out, rest = np.zeros(len(gram)), np.arange(len(gram))
        for order in (3, 2, 1, 0):
            string = gram[rest] & np.uint32(_mask(order + 1))
            at = np.minimum(np.searchsorted(self.strings[order], string), len(self.strings[order]) - 1)
            known = self.strings[order][at] == string
            out[rest[known]] += self.cost[order][at[known]]
            rest, context = rest[~known], string[~known] >> np.uint32(8)
            at = np.minimum(np.searchsorted(self.contexts[order], context), len(self.contexts[order]) - 1)
            seen = self.contexts[order][at] == context
            out[rest[seen]] += self.escape[order][at[seen]]
        out[rest] += np.log(256)
        return out


def _mask(size: int) -> int:
    return (1 << 8 * size) - 1


@dataclass
class Model:
    langs: list[str]
    frozen: list[Language]

    def code_lengths(self, texts: list[np.ndarray], chunk: int = _CHUNK) -> np.ndarray:
        """Nats per text and language; texts from coded(), none of them empty."""
        out = np.zeros((len(texts), len(self.langs)))
        held, size = [], 0
        for i, text in enumerate(texts):
            for start in range(3, len(text), chunk):  # a piece begins with the three bytes before it
                held.append((i, text[start - 3 : start + chunk]))
                size += len(held[-1][1])
                if size >= chunk:
                    self._add(held, out)
                    held, size = [], 0
        if held:
            self._add(held, out)
        return out

    def _add(self, pieces: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        gram, place = np.unique(np.concatenate([_grams(b) for _, b in pieces]), return_inverse=True)
        row = np.repeat(np.arange(len(pieces)), [len(b) - 3 for _, b in pieces])
        of = np.array([i for i, _ in pieces])
        for k, language in enumerate(self.frozen):
            np.add.at(out[:, k], of, np.bincount(row, language.code(gram)[place], len(pieces)))


def train(docs: DataFrame, fold: Column | None = None, *, docs_per_lang: int = DOCS_PER_LANG, grams_per_lang: int = GRAMS_PER_LANG) -> Model | None:
    """Learn from docs (doc_id, text, lang) where fold holds; None if no row can be learned from."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if fold is not None:
        rows = rows.where(fold)
    found = rows.groupBy("lang").count().collect()  # a row per language
    if not found:
        return None
    share = F.create_map(*[x for r in found for x in (F.lit(r["lang"]), F.lit(docs_per_lang / r["count"]))])
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20)) < share[F.col("lang")])

    def count(batches):
        held: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for part in slices(batch):
                for text, lang in zip(column(part, "text"), column(part, "lang"), strict=True):
                    if len(b := coded(text)):
                        held.setdefault(lang, []).append(_grams(b))
                for lang, grams in held.items():
                    keys, n = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])
                held.clear()
        give_back()

    grams = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))  # of what docs_per_lang documents hold
    kept = grams.withColumn("place", place).where(F.col("place") <= grams_per_lang).select("lang", "gram", "n").toPandas()
    if not len(kept):
        return None
    by = {lang: rows for lang, rows in kept.groupby("lang")}
    langs = sorted(by)
    return Model(langs, [Language.freeze(by[lang]["gram"].to_numpy(np.int64), by[lang]["n"].to_numpy(np.float64)) for lang in langs])


def predict(docs: DataFrame, model: Model | None, whole: bool = False) -> DataFrame:
    """doc_id, lang_pred and score of every whole text; with whole=True all columns of docs, then lang_pred and score (columns
    of docs with these names make way)."""
    docs = docs.drop("lang_pred", "score") if whole else docs.select("doc_id", "text")
    held = shared(docs.sparkSession, model)
    schema = T.StructType([f for f in docs.schema.fields if whole or f.name == "doc_id"] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        model = held.value
        for batch in batches:
            for part in slices(batch):
                texts = column(part, "text")
                lang, score = ["und"] * len(texts), [0.0] * len(texts)
                ready = [(i, b) for i, t in enumerate(texts) if t and model is not None and len(b := coded(t))]
                if ready:
                    nats = model.code_lengths([b for _, b in ready])
                    best = nats.argmin(1)
                    post = 1 / np.exp(np.maximum(nats.min(1, keepdims=True) - nats, -700)).sum(1)
                    for (i, _), k, p in zip(ready, best.tolist(), post.tolist(), strict=True):
                        lang[i], score[i] = model.langs[k], min(1.0, p)
                rest = part if whole else part.select(["doc_id"])
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*rest.schema.names, "lang_pred", "score"])
        give_back()

    return docs.mapInArrow(run, schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, crc_mod("doc_id", 4) != 2)
    return predict(docs, model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
